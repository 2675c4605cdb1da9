"""Column expressions of the promo domain (built-in functions only)."""
