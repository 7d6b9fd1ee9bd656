"""Column expressions (no Python per row) used inside the operators."""
