"""Scans and sinks of the layout corpus."""
