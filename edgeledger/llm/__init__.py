"""Operators of a training-data pipeline over documents, each by a method of its own."""
