"""Column expressions; all built-in, none of them Python per row."""
