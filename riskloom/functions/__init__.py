"""Column expressions: every function here returns a Column, never touches a row in Python."""
