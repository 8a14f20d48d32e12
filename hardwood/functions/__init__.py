"""Column expressions: rounding and casting rules, and season rules."""
