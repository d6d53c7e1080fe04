"""Data steps: each takes DataFrames and returns a DataFrame."""
