"""Composed jobs: the view catalog, the ingest run, the registered queries."""
