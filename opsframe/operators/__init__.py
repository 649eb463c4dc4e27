"""Queries, routing, drift, inference, review and guarded SQL."""
