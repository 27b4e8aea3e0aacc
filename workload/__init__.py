"""The test workload: transit data derived from the star tables, queries and oracles."""
