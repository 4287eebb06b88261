"""Typed scans and sinks."""
