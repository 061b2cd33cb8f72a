"""Incremental backup driven by Structured Streaming instead of an external scheduler."""
