"""Analytics on DNS identifier health as Spark DataFrame operators."""
