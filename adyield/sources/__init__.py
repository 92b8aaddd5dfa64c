"""Schemas, scans and sinks."""
