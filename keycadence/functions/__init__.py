"""Column expressions: rounding, time, labels and text scoring."""
