"""Column expressions: dates, text, money and value cleaning."""
