"""Layered public-spending analytics on Spark: raw -> trusted -> mart -> features -> serving."""

__version__ = "0.1.0"
