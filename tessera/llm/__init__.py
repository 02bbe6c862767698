"""Operators of a large-scale training-data pipeline (see each module's docstring)."""
