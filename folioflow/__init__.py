"""Corpus, metadata and graph transformations expressed as Spark DataFrames."""
