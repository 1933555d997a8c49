"""Structured Streaming: files in micro-batches, replays, stale rows, hourly counts."""
