"""Pipelines over company tables. Inputs are DataFrames with the documented columns."""
