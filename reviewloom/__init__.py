"""Customer-review analytics as PySpark DataFrame operators."""
