"""Table operators: inventory, completeness, live partitions, joins, gating, run log, evaluation."""
