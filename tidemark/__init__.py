"""Hierarchical demand analytics on PySpark."""
