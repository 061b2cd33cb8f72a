"""Catalog reads and partition-key listings."""
