"""Query catalogue: named Spark queries with their DuckDB oracle SQL."""
