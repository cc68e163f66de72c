"""Tiered retail event analytics on Spark DataFrames and Structured Streaming."""
