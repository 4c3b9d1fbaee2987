"""Document-intelligence analytics as composable Spark DataFrame transforms."""
