"""DataFrame operators: filters, splits, ordering, joins, encoding, text, vectors."""
