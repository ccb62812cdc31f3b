"""DataFrame -> DataFrame operators (projections, joins, windows, aggregates, generators)."""
