"""Composed plans: the enriched-bar flow and the named query catalog."""
