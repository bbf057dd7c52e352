"""Structured Streaming forms of scoring and alerting."""
