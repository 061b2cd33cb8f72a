"""Composite jobs: loads, retention, validation report, batch runs, query registry."""
