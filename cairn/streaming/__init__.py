"""Structured Streaming jobs: JSON sources, event-time windows, sinks."""
