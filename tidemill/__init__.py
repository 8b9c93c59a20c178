"""Shop-activity analytics on Spark: logs, database changes, order facts, window statistics."""
