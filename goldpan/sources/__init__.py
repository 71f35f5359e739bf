"""Readers, bindings from stored tables to the logical order model, and writers."""
