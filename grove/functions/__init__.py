"""Column expressions: losses, derivatives, probabilities and tree routing."""
