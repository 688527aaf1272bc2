"""Longitudinal panels from overwritten snapshot files, expressed in Spark DataFrames."""
