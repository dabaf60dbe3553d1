"""Tabular regression and monitoring jobs on Spark DataFrames."""

__version__ = "0.1.0"
