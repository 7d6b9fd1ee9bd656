"""Structured Streaming forms of the progress and lifecycle operators."""
