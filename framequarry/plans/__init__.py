"""Whole jobs, and the registered queries with the SQL that checks them."""
