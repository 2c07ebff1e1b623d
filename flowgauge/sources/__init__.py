"""Reading and writing: CSV by name or position, Parquet, JSON, reports, models."""
