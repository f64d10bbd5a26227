"""PySpark toolkit for scoring card transactions in batch and in stream."""

__version__ = "0.1.0"
