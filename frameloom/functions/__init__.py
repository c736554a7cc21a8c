"""Column builders: scores, colours, texts, arrays."""
