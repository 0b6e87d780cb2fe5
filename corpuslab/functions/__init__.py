"""Column expressions over strings, token arrays and vectors."""
