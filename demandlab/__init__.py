"""Retail demand building and forecast evaluation on Spark DataFrames."""
