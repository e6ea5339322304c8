"""Operators on text corpora: the pieces of a training-data pipeline, each with its own general interface."""
