"""Operators for training-data pipelines: tokens, mixing, shards, licences, dialogues, search, duplicates, toxicity."""
