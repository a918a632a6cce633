"""Operators of a training-data pipeline: filters, near duplicates, models, mixing, pieces."""
