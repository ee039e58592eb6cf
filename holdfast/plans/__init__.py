"""Reports and models, each a function from DataFrames to a DataFrame."""
