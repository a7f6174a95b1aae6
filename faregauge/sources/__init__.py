"""Readers of trip files, weather files and zone tables, and their sinks."""
