"""Structured Streaming forms of the windowed page-view counts."""
