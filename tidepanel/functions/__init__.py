"""Column expressions and the tail probabilities of the test statistics."""
