"""Curation of speech-and-text corpora on Spark."""
