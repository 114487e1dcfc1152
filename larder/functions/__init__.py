"""Column helpers.  Everything here is a built-in expression, never a UDF."""
