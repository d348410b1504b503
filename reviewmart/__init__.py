"""Batch review analytics on Spark: staging, star schema, checks and dashboard queries."""
