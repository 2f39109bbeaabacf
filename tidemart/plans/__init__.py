"""Plans: one function per warehouse dataset, DataFrames in, DataFrame out."""
