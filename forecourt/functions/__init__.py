"""Column expressions: no function here runs Python per row."""
