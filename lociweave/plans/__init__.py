"""Assay-level compositions of the operators."""
