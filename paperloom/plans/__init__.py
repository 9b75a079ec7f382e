"""Plans: the stages as one flow, and the registered queries with their DuckDB counterparts."""
