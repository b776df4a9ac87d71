"""Column expressions: text measures, draws, statistics."""
