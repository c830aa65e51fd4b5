"""Column functions: text, geometry, values."""
