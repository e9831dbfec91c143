"""Customer revenue, engagement and loyalty analytics as PySpark DataFrame operators."""
