"""Readers, audit columns, table sinks and scratch storage."""
