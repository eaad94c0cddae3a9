"""Joins, top-n selections and the nearest-site search."""
