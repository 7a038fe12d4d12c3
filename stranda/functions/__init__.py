"""Column functions: geometry of intervals and windows, sequences, attributes, stable hashing."""
