"""Operators: from DataFrames to DataFrames, lazy, without side effects."""
