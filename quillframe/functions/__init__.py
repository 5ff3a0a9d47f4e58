"""Column expressions: arithmetic, text, dates, arrays, special functions."""
