"""Daily point-of-sale reports to a checked star schema, on Spark."""
