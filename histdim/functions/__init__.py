"""Column expressions (built-in Catalyst functions only)."""
