"""Column -> Column expressions for text and amount cleaning."""
