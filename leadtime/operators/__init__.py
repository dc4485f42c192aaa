"""DataFrame operators: clean, joins, aggregates, windows, sets, graph,
sampling and evaluation."""
