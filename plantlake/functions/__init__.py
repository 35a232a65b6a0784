"""Column and expression helpers."""
