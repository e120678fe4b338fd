"""Whole jobs: loads, maintenance, reports."""
