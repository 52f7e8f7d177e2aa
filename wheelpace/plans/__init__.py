"""Whole runs: preparation, statistics, charts and model over one cleaned table."""
