"""Spark-native engine for collections of bibliographic and document metadata."""

__version__ = "0.1.0"
