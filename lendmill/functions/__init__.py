"""Column expressions: finance features and lending policy."""
