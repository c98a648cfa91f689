"""Retail sales extracts in, one clean, typed, checked and enriched sales table out - on Spark."""
