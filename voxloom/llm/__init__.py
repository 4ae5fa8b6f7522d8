"""Operators for training data made of speech transcripts. Nothing else in the library imports this package."""
