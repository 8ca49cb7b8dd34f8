"""Commerce analytics on Spark: audited ingest, flagged silver entities, gold marts and reports."""
