"""Next-best-offer analytics as Spark DataFrame operators."""
