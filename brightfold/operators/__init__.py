"""Operators: DataFrames and fitted Spark ML stages in, DataFrames out."""
