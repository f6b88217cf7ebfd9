"""Layer builders composed from operators: bronze, silver, star schema, analytics."""
