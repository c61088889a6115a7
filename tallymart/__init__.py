"""Daily retail sales tables on Spark."""
