"""Leakage-safe prediction panels as PySpark DataFrame operators."""
