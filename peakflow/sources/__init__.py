"""Readers, test-table bindings and sinks."""
