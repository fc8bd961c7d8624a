"""Column-level functions: literal predicates and derived metrics."""
