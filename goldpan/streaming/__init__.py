"""Ingest of files as they arrive."""
