"""Structured Streaming: per-event features from keyed customer state."""
