"""Readers, writers and fault injection."""
