"""DataFrame -> DataFrame operators (lazy; no collect except fitted parameters)."""
