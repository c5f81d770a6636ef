"""Registered queries: every operator over the given tables, each with the SQL
that says what it must return."""
