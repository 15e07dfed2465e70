"""Retail sales analytics on Spark: raw files to clean tables, metrics and dated reports."""

__version__ = "0.1.0"
