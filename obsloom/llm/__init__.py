"""Operators for the text side of a training-data pipeline; nothing outside this package imports it."""
