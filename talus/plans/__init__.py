"""Whole plans: one scenario, many scenarios, a configured run."""
