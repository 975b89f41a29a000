"""Operators on artifact tables. Each takes and returns lazy DataFrames."""
