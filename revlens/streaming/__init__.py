"""Structured Streaming: message sources, scoring, replay-safe sinks."""
