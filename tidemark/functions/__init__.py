"""Column expressions: cell clean-up, named predicates, fixed values, rules."""
