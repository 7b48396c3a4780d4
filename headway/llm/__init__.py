"""Operators for preparing training text: tokens, languages, duplicates, filters, extraction.

Nothing else in the library imports this package. Every operator takes and returns DataFrames.
"""
