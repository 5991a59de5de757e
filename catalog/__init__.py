"""Queries over the test tables, and the SQL that must agree with them."""
