"""Operators: pure functions from DataFrames to DataFrames. Changes return the new relation and, apart, its delta."""
