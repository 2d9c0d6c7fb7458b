"""Operators for training-text pipelines; nothing outside this package imports it."""
