"""Readers of raw files and tables, and writers."""
