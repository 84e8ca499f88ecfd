"""Streaming re-expression of the ingest step."""
