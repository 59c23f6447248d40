"""Column builders: canonical text, classification, equality and measures."""
