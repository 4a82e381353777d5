"""Readers that turn delimited omics files into typed DataFrames."""
