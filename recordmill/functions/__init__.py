"""Column expressions: text, URLs, names, dates, HTML and JSON."""
