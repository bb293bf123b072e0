"""Structured Streaming wrapper: the daily poll as a stream over a landing directory."""
