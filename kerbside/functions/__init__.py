"""Column expressions: JSON pages, clocks, labels and route lines."""
