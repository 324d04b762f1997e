"""Column expressions: text, dates, vectors and ranking weights."""
