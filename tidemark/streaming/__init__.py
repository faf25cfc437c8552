"""Structured Streaming forms of the hourly refresh."""
