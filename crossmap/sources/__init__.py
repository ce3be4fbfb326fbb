"""Readers, writers and the framework dimension."""
