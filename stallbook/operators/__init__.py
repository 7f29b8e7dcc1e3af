"""DataFrame-to-DataFrame operators: rows, joins, windows, shared results."""
