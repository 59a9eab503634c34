"""Operators that prepare training text: cleaning, deduplication, scoring, tokenising and packing of documents."""
