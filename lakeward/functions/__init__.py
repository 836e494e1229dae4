"""Column expressions and the contract type vocabulary."""
