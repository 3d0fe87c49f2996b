"""E-commerce analytics on Spark: ingest, star schema, quality, marts, streams."""
