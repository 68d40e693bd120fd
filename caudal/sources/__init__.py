"""Readers, writers and data sources."""
