"""The three layers, composed from the operators."""
