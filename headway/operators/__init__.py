"""DataFrame operators. They take column names or specs, so they serve any table."""
