"""Column functions: no DataFrames, no Python UDFs."""
