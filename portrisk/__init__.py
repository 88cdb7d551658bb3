"""Port-risk news analytics as composable Spark DataFrame operators."""
