"""Query catalogue over the driver's test tables (landing adapters, queries, oracle SQL)."""
