"""Read-models and whole jobs composed from the operators."""
