"""Structured Streaming form of the load program (the original has no streaming
operators; this runs the same enrichment incrementally as flight files arrive)."""

from tarmac.streaming.incremental import enrich_stream, incremental_load  # noqa: F401
