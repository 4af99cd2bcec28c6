"""Structured Streaming form of the signal flow."""
