"""Operators of a large-scale training-data pipeline, one module per method.

Every module has a general operator (DataFrames in, DataFrames out); the thin
registered queries over the driver tables are in ``queries.py`` and their
DuckDB SQL in ``oracle.py``.
"""
