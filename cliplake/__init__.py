"""Batch analytics for short-form video datasets, expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
