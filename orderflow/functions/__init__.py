"""Column helpers; every one returns built-in Spark expressions."""
