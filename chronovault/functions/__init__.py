"""Column expressions: text, metric maps, identity, numbers."""
