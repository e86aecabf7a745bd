"""Column functions: text, dates, value maps and identifiers."""
