"""Relational operators: cleaning, columns, lookups, quantiles, ordering, aggregates."""
