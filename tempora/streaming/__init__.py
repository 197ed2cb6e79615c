"""Streaming of the temporal engine."""
