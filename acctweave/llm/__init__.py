"""Operators for preparing training text: extraction, dedup, classification, packing, tokens."""
