"""Physical building blocks (lineage cuts, skew-safe joins) and the query catalogue."""
