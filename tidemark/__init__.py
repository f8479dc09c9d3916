"""Event-time analytics operators for PySpark tables and streams."""
