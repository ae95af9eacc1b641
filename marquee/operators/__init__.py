"""The building blocks: DataFrames in, a DataFrame out."""
