"""Rulesets, analytics over the warehouse, and the daily run."""
