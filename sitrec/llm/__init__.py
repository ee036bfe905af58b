"""Operators that prepare training text: deduplication, filtering, tokens, mixing, packing."""
