"""Operators for large text corpora: language, quality, duplicates, mixing, sharding, tokens and packing."""
