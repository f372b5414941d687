"""Operators of a training-data pipeline (numbered as in the README)."""
