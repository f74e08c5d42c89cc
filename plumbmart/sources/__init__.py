"""Scans, source contracts, seeds and sinks."""
