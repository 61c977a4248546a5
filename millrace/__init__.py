"""Declarative bronze/silver ingestion and SCD table maintenance on plain Apache Spark."""

__version__ = "0.1.0"
