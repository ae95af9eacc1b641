"""Writers: Parquet tables, vote stores and message topics."""
