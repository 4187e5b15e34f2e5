"""Operators for preparing training text: near and exact duplicates, classifiers, scans,
tokens, packing and web archives. Nothing else in the library imports this package."""
