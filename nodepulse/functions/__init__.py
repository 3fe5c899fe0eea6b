"""Column expressions.  Nothing here starts a job or touches rows in Python."""
