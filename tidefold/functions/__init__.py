"""Column functions: log positions, payload fields, names, hashes and types."""
