"""Relational, statistical and audit operators, free of any one domain."""
