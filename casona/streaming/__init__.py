"""Structured Streaming forms of arrivals, logs and costs."""
