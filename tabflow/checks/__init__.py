"""Registered queries on the given tables, and the SQL each must agree with."""
