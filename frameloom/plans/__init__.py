"""Queries over the driver's tables, their SQL, and staged pipelines."""
