"""Structured Streaming: raw landing, typed topics, routing, stateful operators."""
