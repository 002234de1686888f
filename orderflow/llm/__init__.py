"""Operators of a training-data pipeline over documents, pages, labels and conversations."""
