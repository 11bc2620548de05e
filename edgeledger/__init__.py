"""Address-translation session analytics as PySpark DataFrame operators."""
