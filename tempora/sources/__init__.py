"""Sources of the temporal engine."""
