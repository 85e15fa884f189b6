"""Jobs that take DataFrames and return a DataFrame."""
