"""Change-feed ingestion and keyed merge on Spark."""
