"""Incremental counterparts of the batch build."""
