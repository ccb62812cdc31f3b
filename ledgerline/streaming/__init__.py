"""Structured Streaming form of the registry sync."""
