"""Column expressions: text, arrays and reproducible random keys."""
