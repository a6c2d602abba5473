"""Whole pipelines, and the operators bound to the driver tables."""
