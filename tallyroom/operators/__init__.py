"""The operators: DataFrames in, DataFrame out. None of them starts a job."""
