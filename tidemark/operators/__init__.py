"""DataFrame operators. All take column names, so they run on any table."""
