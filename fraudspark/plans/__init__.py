"""Batch jobs and the query catalog."""
