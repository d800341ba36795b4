"""Structured Streaming forms of the incremental loads (K1-K4)."""
