"""The three jobs: ingest, etl, analysis."""
