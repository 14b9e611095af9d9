"""Analyses for tables, workloads and data models in a data lake, as Spark jobs."""

__version__ = "0.1.0"
