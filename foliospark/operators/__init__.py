"""Reusable DataFrame operators: time selection, symbol resolution, tracing, shares of a total."""
