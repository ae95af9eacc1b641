"""Readers: text dumps, Parquet tables, vote messages and the vote log."""
