"""Spark jobs that prepare captioned image sets and text corpora for training."""
