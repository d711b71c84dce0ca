"""Smart-meter energy analytics as PySpark DataFrame operators."""
