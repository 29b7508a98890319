"""Sources: JSON landing feeds, catalog tables, and feeds mapped from the shared test tables."""
