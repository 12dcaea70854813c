"""Queries over flight legs and weather: DataFrames and Params in, DataFrame out."""
