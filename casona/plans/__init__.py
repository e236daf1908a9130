"""End-to-end plans: the ingest stages, the flagship report and the query catalogue."""
