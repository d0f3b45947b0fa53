"""Column functions that bridge physical Parquet values and logical types."""
