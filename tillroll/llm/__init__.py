"""Operators for training-data pipelines: one module each, applied to whole tables."""
