"""Late-event analytics on Spark: clean trip records, attach weather, learn delays."""
