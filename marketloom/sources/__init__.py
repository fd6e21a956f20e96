"""Readers, writers and versioned tables."""
