"""The silver and gold tables as functions from DataFrames to DataFrames."""
