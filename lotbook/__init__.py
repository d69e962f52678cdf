"""Batch warehouse loads for multi-channel car sales, written as PySpark DataFrame jobs."""
