"""Column expressions: geography, time and text."""
