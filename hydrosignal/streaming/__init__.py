"""Structured Streaming forms of the hourly, event, state and scoring operators."""
