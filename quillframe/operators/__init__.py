"""Relational operators: projection, missing data, joins, aggregation, windows, order, sets."""
