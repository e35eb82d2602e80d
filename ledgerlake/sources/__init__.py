"""Readers, versioned tables and ingestion steps."""
