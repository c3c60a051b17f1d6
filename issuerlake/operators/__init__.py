"""DataFrame operators. Every function takes and returns DataFrames and runs on the executors."""
