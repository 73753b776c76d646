"""Readers and writers for raw documents and model tables."""
