"""Query registry (Spark side) and SQL oracle strings."""
