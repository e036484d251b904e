"""Scans, sinks, layouts and the mapping of raw tables to the domain."""
