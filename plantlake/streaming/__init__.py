"""Structured Streaming sinks."""
