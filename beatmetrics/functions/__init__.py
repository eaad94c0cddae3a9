"""Column expressions and distance columns."""
