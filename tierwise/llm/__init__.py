"""Operators over text corpora for building training data."""
