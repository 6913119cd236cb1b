"""Readers, sinks and landing checks."""
