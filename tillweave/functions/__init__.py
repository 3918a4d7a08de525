"""Column expressions: text, numbers and dates."""
