"""Batch and streaming analytics as plain PySpark DataFrame and SQL jobs."""
