"""DataFrame -> DataFrame operators over panel tables."""
