"""Column-level building blocks: numbers, symbols, metrics and ordered rules."""
