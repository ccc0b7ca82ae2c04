"""Customer-attrition analytics as lazy PySpark DataFrame operators."""
