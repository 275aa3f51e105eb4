"""Operators that prepare training text: duplicates, filters, mixing, sharding, packing."""
