"""Readers, writers and small state."""
