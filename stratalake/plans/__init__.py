"""Layer-to-layer plans built from the operators."""
