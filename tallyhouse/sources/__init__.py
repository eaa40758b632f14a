"""Table schemas, the mapping from the given tables, and snapshot tables."""
