"""DataFrame operators: cleaning, joins, upserts, statistics and models."""
