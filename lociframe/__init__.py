"""Population-genomics analytics as PySpark DataFrame operators."""
