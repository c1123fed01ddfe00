"""Ordered-document analytics on Spark: elements in, intervals and reports out."""

__version__ = "0.1.0"
