"""Operators that prepare text for language models."""
