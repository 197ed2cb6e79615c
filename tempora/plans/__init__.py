"""Plans of the temporal engine."""
