"""Column expressions: names, keys, ranges, dates and sizes."""
