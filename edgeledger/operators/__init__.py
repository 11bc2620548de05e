"""Operators; each takes and returns DataFrames and runs nothing by itself."""
