"""Incremental runs: what is due, what is fresh, and streams over landing folders."""
