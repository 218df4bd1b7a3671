"""Readmission analytics on Spark: ingest, features, model preparation, training and scoring."""

__version__ = "0.1.0"
