"""Column expressions: text, time, sentiment and ordering keys."""
