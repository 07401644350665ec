"""Lathework: preparing wide mixed-type tables and searching for regression models on Spark."""

__version__ = "0.1.0"
