"""Table operators: page extraction, curation, joins, aggregation, lifecycle."""
