"""Operators for a training-data pipeline: one module per operator, their named queries in ``queries``."""
