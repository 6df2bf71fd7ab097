"""Behaviour-log analytics as PySpark DataFrame jobs."""
