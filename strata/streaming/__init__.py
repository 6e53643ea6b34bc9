"""Structured Streaming form of the record flow."""
