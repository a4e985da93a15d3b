"""Column expressions: text, dates, numbers. No Python runs per row."""
