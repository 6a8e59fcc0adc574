"""Whole jobs: ingest, the two reports, the running analyses."""
