"""Scans, raw-record mapping, page parsing and sinks."""
