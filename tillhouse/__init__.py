"""Retail sales warehouse on Spark: layered ingest, row quarantine, star schema, analytics."""
