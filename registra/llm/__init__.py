"""Operators of a large-scale training-data pipeline; nothing outside this subpackage imports it."""
