"""Column-level helpers; every one returns a Column built from built-in functions."""
