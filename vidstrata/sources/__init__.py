"""Readers: file discovery, JSON lines, channel CSV, relational tables."""
