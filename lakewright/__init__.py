"""Data-lake operations as plain functions over Spark DataFrames."""

__version__ = "0.1.0"
