"""Column expressions: keys, dates, rounding and outlier rules."""
