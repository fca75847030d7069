"""Medallion analytics for JSON event streams, written on Spark DataFrames."""

__version__ = "0.1.0"
