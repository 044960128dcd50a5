"""Structured Streaming: running queries, replay-safe sinks, keyed state with timers."""
