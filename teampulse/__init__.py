"""Community engagement analytics as Spark DataFrame operators."""
