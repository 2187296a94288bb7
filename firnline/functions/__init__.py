"""Column expressions: physics, geometry, per-trace arrays and values."""
