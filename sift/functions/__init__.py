"""Column expressions: name handling and text coercion."""
