"""The datasets users query, each a function from input DataFrames to one DataFrame."""
