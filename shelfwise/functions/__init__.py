"""Scalar expressions, all made of built-in Spark functions."""
