"""Scans, files and tables."""
