"""Operators over text corpora and embeddings for the preparation of training data.

Nothing else in the library imports this subpackage.
"""
