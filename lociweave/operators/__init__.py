"""DataFrame -> DataFrame operators; every output is keyed by the caller's key columns."""
