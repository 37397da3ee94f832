"""DataFrame operators; table and column names are arguments."""
