"""Operators for training-data pipelines: de-duplication, filtering, redaction, packing and formatting."""
