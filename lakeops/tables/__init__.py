"""Stored tables: versioned tables on Parquet, and the session catalog."""
