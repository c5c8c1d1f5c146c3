"""DataFrame -> DataFrame operators: aggregates, ranking, joins, set ops, cleaning, graph."""
