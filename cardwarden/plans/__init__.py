"""Whole runs over a warehouse, and the same steps over the test tables."""
