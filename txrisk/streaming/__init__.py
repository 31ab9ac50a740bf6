"""Incremental batch progress: batch bounds and stored high-water marks.

The jobs are incremental batches; there is no Structured Streaming and no event-time watermark.
"""
