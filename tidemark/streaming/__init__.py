"""Structured Streaming form of the incremental job."""
