"""Column expressions: text cleaning, splitting, keys."""
