"""Labelled-text lakehouse on Spark: ingest, clean, profile, split, featurise, train, watch, score."""
