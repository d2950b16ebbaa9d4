"""Whole runs, and the named queries with the SQL that checks them."""
