"""Column expressions: text cleaning, scoring and shingle fingerprints."""
