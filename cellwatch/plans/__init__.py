"""Query plans: the pipeline wiring, the query registry and the SQL oracles."""
