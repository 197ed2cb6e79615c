"""Functions of the temporal engine."""
