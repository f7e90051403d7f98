"""Table-level operators: de-duplication, joins, maintenance, sinks, checks and run log."""
