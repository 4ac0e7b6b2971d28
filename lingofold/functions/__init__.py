"""Column functions: codes, text, vectors and row errors."""
