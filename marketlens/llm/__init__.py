"""Operators of a training-data pipeline: privacy, tokens, sharding, archives, duplicates, quality."""
