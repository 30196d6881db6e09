"""Scans and sinks: driver tables, derived raw inputs, drift-tolerant readers, writers."""
