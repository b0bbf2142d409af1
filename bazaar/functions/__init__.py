"""Column functions: text, dates, numbers, nested JSON and stored HTML."""
