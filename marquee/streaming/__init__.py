"""Incremental ingest, change tables and the refresh job."""
