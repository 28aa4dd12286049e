"""DataFrame operators. Each takes and returns DataFrames and runs no job."""
