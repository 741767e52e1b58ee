"""Model builders, the named query catalog and its SQL oracle."""
