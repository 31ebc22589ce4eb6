"""Reading and landing: JSON documents, Parquet layers, the load ledger."""
