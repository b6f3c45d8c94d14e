"""Operators of a training-data pipeline: web archives, text, similarity search, mixing and tokens."""
