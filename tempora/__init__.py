"""Temporal analytics on PySpark: DataFrame-in, DataFrame-out operators over events and transcripts."""
