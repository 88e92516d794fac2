"""Forecourt: sales, inventory and lead analytics expressed as Spark jobs."""

__version__ = "0.1.0"
