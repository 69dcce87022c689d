"""Fit/transform steps over DataFrames."""
