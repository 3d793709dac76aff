"""Operators: pure functions from DataFrames to a DataFrame."""
