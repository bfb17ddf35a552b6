"""Column builders and the fixed values they use."""
