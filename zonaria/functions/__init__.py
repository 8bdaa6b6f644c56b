"""Column expressions (no UDF): text, geometry, projections, scales."""
