"""Gridded and station weather series as Spark DataFrames."""
