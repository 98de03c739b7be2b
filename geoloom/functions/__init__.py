"""Column expressions: geometry, projections, scalar rules."""
