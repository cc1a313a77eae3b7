"""Operators of a training-data pipeline, each a set of Spark jobs over whole tables.

One module per operator; ``queries`` registers one query for each of them and
``oracle_sql`` holds the DuckDB text of those that SQL can express. Nothing else in
the package imports this subpackage.
"""
