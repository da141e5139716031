"""Bulk document ingestion and training-data preparation on Spark."""
