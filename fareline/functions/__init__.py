"""Column functions: everything here builds expressions, nothing touches data."""
