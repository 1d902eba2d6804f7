"""Readers for files, drops, databases and date spines."""
