"""Batch analytics over e-commerce click logs, on Spark DataFrames."""

__version__ = "0.1.0"
