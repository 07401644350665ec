"""Operators for preparing training text: extraction, filters, deduplication, scoring, mixing, packing."""
