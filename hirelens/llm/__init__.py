"""Operators for preparing training data from web corpora."""
