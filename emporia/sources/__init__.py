"""Scans, adapters, sinks and the data lake."""
