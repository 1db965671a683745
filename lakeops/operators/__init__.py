"""Operators which take and return DataFrames."""
