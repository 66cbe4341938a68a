"""Structured Streaming form of the feed enrichment."""
