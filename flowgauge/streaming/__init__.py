"""Structured Streaming: score flows with saved members and emit alerts."""
