"""Versioned, quality-checked fact tables as PySpark DataFrame operators."""

__version__ = "0.1.0"
