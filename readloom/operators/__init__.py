"""Functions from DataFrames to a DataFrame, one for each operation on reads, counts, reports and runs."""
