"""Structured Streaming jobs. Each builder also accepts a batch of messages."""
