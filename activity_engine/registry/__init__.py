"""Queries over the given tables, and the SQL that states their expected results."""
