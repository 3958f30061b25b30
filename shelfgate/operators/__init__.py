"""Operators: DataFrame -> DataFrame building blocks (rules, gate, keys, audit, profile)."""
