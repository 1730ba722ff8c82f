"""Network tables as DataFrames."""
