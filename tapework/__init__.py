"""End-of-day market-data analytics as composable Spark DataFrame operators."""
