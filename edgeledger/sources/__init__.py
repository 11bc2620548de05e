"""Readers of log folders, stored tables and dimensions."""
