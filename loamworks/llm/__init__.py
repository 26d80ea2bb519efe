"""Operators a training-data pipeline needs; optional, nothing else in the library imports this."""
