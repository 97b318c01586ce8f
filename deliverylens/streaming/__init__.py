"""Structured Streaming: file feeds to bronze, keyed upserts (stateful and foreachBatch)."""
