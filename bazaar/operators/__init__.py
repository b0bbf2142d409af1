"""DataFrame operators: contracts, headers, filters, joins, dedupe, upsert, reshape."""
