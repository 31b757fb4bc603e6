"""Column and DataFrame building blocks."""
