"""Queries over the given tables: the library's operators in the roles of SURVEY section 7.4."""
