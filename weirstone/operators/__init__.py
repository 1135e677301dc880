"""Operators over DataFrames: DataFrames and plain parameters in, DataFrame out."""
