"""Operators for building training data: filters, joins, sampling, tokens."""
