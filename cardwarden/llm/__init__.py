"""Operators for large training-text corpora and the pipeline that joins five of them."""
