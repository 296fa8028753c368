"""Operators for large-scale training-data preparation.

Each module holds one operator with its own general interface; ``queries.py``
applies them to the given tables, ``oracle.py`` has the SQL of those that SQL
can express.  Nothing outside this subpackage imports it.
"""
