"""Scans: files, catalog tables and generated calendars."""
