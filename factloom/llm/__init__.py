"""Operators for preparing text data for language models. Nothing else in the library imports this package."""
