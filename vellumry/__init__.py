"""Spark-first engine for quality work on scanned and OCR-processed documents."""

__version__ = "0.1.0"
