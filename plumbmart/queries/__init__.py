"""Queries over the benchmark tables, each with an equivalent SQL statement."""
