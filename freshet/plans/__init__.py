"""Stand-in relations over the given tables."""
