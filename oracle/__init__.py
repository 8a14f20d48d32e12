"""The expected results as SQL for the checking engine, over the same Parquet tables."""
