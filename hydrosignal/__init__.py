"""Keyed environmental time-series analytics on Spark DataFrames."""
