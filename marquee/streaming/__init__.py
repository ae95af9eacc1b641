"""Structured Streaming jobs over vote messages."""
