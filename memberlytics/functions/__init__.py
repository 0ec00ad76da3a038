"""Column expressions: dates, numbers in text, scores and profile columns."""
