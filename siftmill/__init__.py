"""Batch data engine for molecule screening and active learning on PySpark DataFrames."""

__version__ = "0.1.0"
