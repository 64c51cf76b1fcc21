"""Operators of a training-data pipeline over documents, pages and labels.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries`` holds the registered queries.
"""
