"""Ready-made queries built from the operators."""
