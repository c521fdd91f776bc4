"""Structured Streaming: incremental intake and request matching."""
