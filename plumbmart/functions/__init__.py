"""Column functions that type raw source tokens."""
