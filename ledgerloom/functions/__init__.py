"""Column expressions: parsing, text, rounding, distributed ranks and quantiles."""
