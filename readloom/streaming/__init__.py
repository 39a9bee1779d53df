"""Windowed trend queries, batch and streaming."""
