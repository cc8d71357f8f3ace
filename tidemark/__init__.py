"""Snapshot analytics as PySpark DataFrame operators."""
