"""DataFrame operators: projection, filters, deduplication, numbering, joins, hot-key handling."""
