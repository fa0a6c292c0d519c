"""Structured Streaming jobs: once-only file intake and the insert-triggered silver view."""
