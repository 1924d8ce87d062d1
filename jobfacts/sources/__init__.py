"""Input relations: parquet readers, the shared code table and the role adapters."""
