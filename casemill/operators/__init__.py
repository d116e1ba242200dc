"""Operators: ``DataFrame -> DataFrame``."""
