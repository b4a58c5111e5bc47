"""Structured Streaming forms of the jobs the batch pipeline re-runs day by day."""
