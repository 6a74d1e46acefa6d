"""Readers, listings and writers."""
