"""Query plans: adapters over the test tables, the query catalogue, full runs."""
