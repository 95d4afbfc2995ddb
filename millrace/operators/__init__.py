"""DataFrame operators: filters, joins, aggregates, latest-value tables and transit state."""
