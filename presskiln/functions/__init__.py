"""Column functions: everything that looks at one row only."""
