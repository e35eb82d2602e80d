"""Event-history analytics as Spark DataFrame operators."""
