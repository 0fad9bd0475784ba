"""Batch engine for a securities-brokerage warehouse, written as Spark DataFrame jobs."""
