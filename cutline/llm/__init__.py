"""Operators for preparing training text: deduplication, filtering, mixing, packing and token output."""
