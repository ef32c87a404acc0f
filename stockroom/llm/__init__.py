"""Operators of a large-scale training-data pipeline (deduplication, quality, mixing, encoding).

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries.py`` registers one query per operator, ``oracle.py`` its DuckDB SQL.
"""
