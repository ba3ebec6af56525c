"""Structured Streaming forms of the keyed upsert and the daily funnel."""
