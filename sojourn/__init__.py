"""Lifecycle analytics over event logs, as Spark DataFrame jobs."""
