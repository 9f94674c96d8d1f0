"""Operators for large training corpora: quality, near duplicates, mixing, tokenising, language models, search."""
