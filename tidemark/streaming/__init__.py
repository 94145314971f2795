"""Nightly loads as Structured Streaming micro-batches."""
