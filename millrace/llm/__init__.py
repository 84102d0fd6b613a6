"""Operators of a training-data pipeline: one module per operator, ``queries`` applies them to the given tables."""
