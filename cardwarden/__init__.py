"""Card-spend analytics on Spark: landing to bronze, silver, gold, scores and checks."""

__version__ = "0.1.0"
