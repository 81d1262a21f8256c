"""Customer-retention analytics as Spark DataFrame operators."""
