"""Column expressions and small row-level transforms."""
