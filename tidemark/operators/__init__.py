"""Single steps, each from DataFrames to DataFrames and lazy."""
