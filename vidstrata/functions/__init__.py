"""Column expressions: loose-type coercion, dates, sketches."""
