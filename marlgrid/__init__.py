"""Batch and streaming analytics operators on Spark DataFrames."""
