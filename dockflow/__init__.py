"""Station flow and inventory analytics as PySpark DataFrame operators."""
