"""Operators of a large-scale training-data pipeline (numbers 1 to 10)."""
