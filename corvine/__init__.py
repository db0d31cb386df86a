"""Corvine: catalog-and-evaluation analytics on Spark DataFrames."""
