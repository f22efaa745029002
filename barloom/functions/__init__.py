"""Column helpers; everything here is a built-in Spark expression."""
