"""Panel analytics on Spark."""
