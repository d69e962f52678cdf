"""Reusable load operators on DataFrames."""
