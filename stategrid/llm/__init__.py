"""Operators for training-data preparation on document, conversation and
embedding tables, and the queries that apply them (``queries.py``). Nothing
else in the library imports this subpackage."""
