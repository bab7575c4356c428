"""Scans, payload readers, keyed writes and sinks."""
