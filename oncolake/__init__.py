"""Patient-indexed cancer research data on Spark: catalog, ingest and cohort reports."""
