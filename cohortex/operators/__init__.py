"""DataFrame operators: sessions, aggregates, joins, sampling, learning, registry, export."""
