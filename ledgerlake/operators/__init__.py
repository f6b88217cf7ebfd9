"""DataFrame -> DataFrame operators; each takes its column names as arguments."""
