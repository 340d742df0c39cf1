"""Structured Streaming: the batch transform on micro-batches, landing-folder
sources and per-session state (counters, bounds) kept in the state store."""
