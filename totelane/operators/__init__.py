"""The steps of a routing run, each from DataFrames to a DataFrame."""
