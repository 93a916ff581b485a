"""Batch and streaming event star schema on Spark DataFrames."""
