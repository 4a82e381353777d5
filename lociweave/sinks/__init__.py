"""Writers and output checks."""
