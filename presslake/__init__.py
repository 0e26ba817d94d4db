"""presslake: harvested web pages → clean, queryable tables, on Spark."""

__version__ = "0.1.0"
