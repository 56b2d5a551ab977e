"""Reusable relational operators: precedence (top-1 per key), the bucketed
event-window join, keyed upserts, and the ingest/worklist operators."""
