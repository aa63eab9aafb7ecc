"""Column expressions: JSON field reading, amounts and the fixed vocabulary."""
