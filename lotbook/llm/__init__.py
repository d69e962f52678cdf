"""Operators for preparing training data: mixing, duplicates, quality, web archives, neighbours, privacy, packing."""
