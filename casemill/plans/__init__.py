"""Whole runs: several operators planned together."""
