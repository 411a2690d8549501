"""Structured Streaming forms of the merge, summary and load jobs."""
