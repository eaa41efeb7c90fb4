"""Column expressions: all built-in functions, no Python in the tasks."""
