"""Structured Streaming runners, and their result tables as change logs and snapshots."""
