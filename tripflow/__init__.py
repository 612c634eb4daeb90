"""Trip analytics over taxi-style GPS segments, as PySpark DataFrame operators."""
