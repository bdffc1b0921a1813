"""Operators over text and vectors for training-data pipelines.

Nothing else in the library imports this package. Each module holds one operator with its own
interface; ``queries.py`` binds them to the test tables.
"""
