"""Batch jobs (spark-submit mains)."""
