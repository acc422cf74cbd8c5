"""DataFrame operators: each takes and returns DataFrames and starts no collection of data."""
