"""Structured Streaming: keyed bounded state and event-time windows."""
