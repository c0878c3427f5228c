"""Property-sale price analytics on Spark: publish, ingest, clean, summarise and serve."""
