"""Column expressions and column-wise steps."""
