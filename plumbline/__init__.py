"""Spark-first analytics for ordered, episode-structured data."""
