"""Joins, scans and aggregations over whole tables."""
