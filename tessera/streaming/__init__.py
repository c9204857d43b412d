"""Incremental (Structured Streaming) form of the log rollup; the analyses themselves are batch."""
