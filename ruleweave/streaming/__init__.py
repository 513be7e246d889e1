"""Structured Streaming: sources, detection by micro-batch with a tail table, idempotent alert sinks."""
