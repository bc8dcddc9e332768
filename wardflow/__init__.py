"""Layered raw / curated / gold data flows as PySpark DataFrame jobs."""
