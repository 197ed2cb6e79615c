"""Operators of the temporal engine."""
