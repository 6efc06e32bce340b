"""Ledger lakehouse on Spark: statements in, classified transaction mart out."""

__version__ = "0.1.0"
