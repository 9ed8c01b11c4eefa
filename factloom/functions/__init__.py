"""Column expressions: hashes, text, vectors."""
