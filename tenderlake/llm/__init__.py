"""Operators a training-data pipeline needs, beside the procurement tables."""
