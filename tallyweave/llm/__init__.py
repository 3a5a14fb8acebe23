"""Operators for large training-text corpora.

Each module holds one operator with a general interface; ``queries`` applies them to the
given tables and registers the result. Nothing else in the library imports this package.
"""
