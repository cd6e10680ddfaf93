"""Ingestion and analytics for networks of organisations, on Spark DataFrames."""
