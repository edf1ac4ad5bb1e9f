"""Structured Streaming variants (T1-T4) of the batch transforms."""
