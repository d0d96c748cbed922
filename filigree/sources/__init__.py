"""Readers of raw registry files and writers of tables."""
