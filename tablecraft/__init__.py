"""Analytics on tables and streams, written as PySpark DataFrame code."""
