"""Event-locked analytics as PySpark DataFrame operators."""
