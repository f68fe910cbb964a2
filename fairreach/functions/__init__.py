"""Column expressions: text, clock, geometry and cost."""
