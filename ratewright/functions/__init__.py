"""Column helpers; each returns a Column or a DataFrame built from built-ins."""
