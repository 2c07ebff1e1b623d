"""Column expressions: hashes, ratios, votes and report text."""
