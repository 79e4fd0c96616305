"""Retail demand, stock and supplier analytics on Spark DataFrames."""
