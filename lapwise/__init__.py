"""Activity analytics on Spark: typed tables, derivations, loads and queries."""
