"""Structured Streaming: the same tables, kept up to date file by file."""
