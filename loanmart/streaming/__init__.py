"""Structured Streaming forms of the webhook flows."""
