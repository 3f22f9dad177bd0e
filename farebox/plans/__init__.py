"""Composed plans: the batch pipeline, view publication, the query registry."""
