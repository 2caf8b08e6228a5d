"""Structured Streaming jobs; each has a batch twin under ``operators``."""
