"""Assign short texts to the codes of a hierarchical taxonomy, on Spark DataFrames."""
