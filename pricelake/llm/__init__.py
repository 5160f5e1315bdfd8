"""Operators for preparing training data (text, vectors, web archives) on Spark.

Nothing else in the library imports this subpackage; its queries are listed in ``queries.py``.
"""
