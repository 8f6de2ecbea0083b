"""Streaming sinks and jobs."""
