"""Column expressions: text, years, dates and paths."""
