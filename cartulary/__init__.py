"""Batch analytics for registry-style data, written as Spark DataFrame jobs."""
