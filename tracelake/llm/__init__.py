"""Operators for training-data pipelines; see the README. Nothing else in the library imports this package."""
