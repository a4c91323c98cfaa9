"""Structured Streaming: events to bars, and micro-batch upserts into a panel."""
