"""Event analytics on Spark: raw JSON -> bronze -> silver -> user dimension -> marts."""
