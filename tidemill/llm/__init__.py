"""Operators that prepare training text: filters, duplicates, search, counts and mixing.

Nothing else in the library imports this package.
"""
