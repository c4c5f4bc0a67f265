"""Structured Streaming: bus messages -> Bronze via foreachBatch."""
