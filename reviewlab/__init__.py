"""Order-review analytics as Spark DataFrame operators."""
