"""Readers, writers and the raw-table adapter."""
