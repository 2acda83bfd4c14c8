"""Column -> Column helpers: analyzers, predicates, projections."""
