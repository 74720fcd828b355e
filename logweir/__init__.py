"""Operational log gathering and normalization as Spark jobs."""
