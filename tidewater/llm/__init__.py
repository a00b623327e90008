"""Operators for preparing text corpora.

Nothing else in the library imports this subpackage. The operators are plain
functions from DataFrames to DataFrames; ``queries.py`` applies each of them to
its whole table.
"""
