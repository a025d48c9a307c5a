"""Operators of a training-data pipeline: cleaning, search, scoring, encoding.

Nothing else in the library imports this package.
"""
