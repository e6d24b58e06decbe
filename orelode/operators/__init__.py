"""The mining operators. Each takes DataFrames and returns DataFrames or a small model."""
