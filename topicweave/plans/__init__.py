"""Whole jobs: embed a corpus, tune the grid, build a topic model."""
