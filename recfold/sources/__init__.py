"""Readers, source checks and shared scratch storage."""
