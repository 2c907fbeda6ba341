"""Scans, sinks and the input frames built from the star-schema tables."""
