"""Structured Streaming jobs over the interaction feed."""
