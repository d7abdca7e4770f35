"""Operators for preparing training text: filter, de-duplicate, clean, pack."""
