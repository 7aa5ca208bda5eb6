"""Structured Streaming forms of the rate and progress operators."""
