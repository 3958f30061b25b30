"""Column functions: canonical schema, casts, predicates."""
