"""Operators that prepare training data: quality, duplicates, secrets, licences, tokens, mixing and packing."""
