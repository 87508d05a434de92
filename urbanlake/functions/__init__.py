"""Column expressions: calendar labels, WKT geometry, derived values."""
