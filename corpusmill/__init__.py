"""Corpus pipeline on Spark: change application, profiling, embedding, vector search and training-data operators."""

__version__ = "0.1.0"
