"""Mirrored sales analytics on Spark: change folding, audits, views, BI queries and mirror monitoring."""

__version__ = "0.1.0"
