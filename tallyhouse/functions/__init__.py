"""Column expressions and aggregates of the report."""
