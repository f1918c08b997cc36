"""Structured Streaming jobs. Each query owns one checkpoint."""
