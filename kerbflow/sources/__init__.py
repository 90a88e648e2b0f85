"""Scans and sinks: trip files, CSV side tables, format comparison, file health."""
