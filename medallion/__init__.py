"""Tabular ETL and batch machine learning as Spark DataFrame jobs."""

__version__ = "0.1.0"
