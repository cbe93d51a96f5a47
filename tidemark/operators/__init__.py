"""Relational operators of the metrics domain; DataFrames in, DataFrames out."""
