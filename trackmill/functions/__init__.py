"""Column expressions: time, geodesy, physics, encodings."""
