"""Structured Streaming runners and stateful operators."""
