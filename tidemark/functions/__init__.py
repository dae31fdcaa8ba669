"""Column expressions on text and time."""
