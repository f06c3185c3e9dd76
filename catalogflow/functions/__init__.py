"""Column expressions: text, money, dates, specs, URLs and status."""
