"""Readers: decoded messages, track files, sidecars, stored tables."""
