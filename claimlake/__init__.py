"""Claims analytics on open-source Spark: typed ingest, row quality, marts, monitoring and severity models."""
