"""Structured Streaming: ingestion, raw landing, windows, sessions, dedup, running 360.

Every stream takes its checkpoint location from the caller (a shared folder
on a cluster), so a restarted or failed query resumes from its offsets and
state. Event time is a ``timestamp`` (instant) column; sources whose time is
a wall-clock ``timestamp_ntz`` are read as UTC wall time.
"""
