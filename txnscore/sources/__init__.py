"""Readers of datasets, record streams and models."""
