"""DataFrame -> DataFrame operators. None of them creates a session or collects data."""
