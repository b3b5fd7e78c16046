"""Operators for large-scale training-data pipelines, on plain Spark DataFrames.

Nothing else in the library imports this subpackage.
"""
