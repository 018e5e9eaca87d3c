"""Order-to-cash analytics on Spark: landing feed to silver facts, dimensions, marts and metrics."""
