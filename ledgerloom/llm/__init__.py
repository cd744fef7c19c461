"""Operators for training-data pipelines, one module per operator.

Nothing outside this subpackage imports it; ``queries`` lists its registered
queries and their DuckDB texts.
"""
