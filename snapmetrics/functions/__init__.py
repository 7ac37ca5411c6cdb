"""Column functions: cleaning and derived rates."""
