"""Column expressions: cleaning, keys, rules."""
