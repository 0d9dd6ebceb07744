"""Scans, derived views, file sources and sinks, schema tools."""
