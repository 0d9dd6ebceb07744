"""Composed report queries and end-to-end cleaning pipelines."""
