"""Structured Streaming twins of the batch replays."""
