"""Vehicle-listing analytics as PySpark DataFrame operators."""
