"""Selects scenario-specific subsets of a large hazard directory, on Spark."""
