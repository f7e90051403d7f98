"""The registered queries: reference domains derived from the given tables, and their oracle SQL."""
