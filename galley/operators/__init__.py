"""Operators of the layout corpus. All take and return DataFrames."""
