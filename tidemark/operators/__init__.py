"""Relations: DataFrames in, DataFrames out."""
