"""Structured Streaming: decoding, starting and writing micro-batches."""
