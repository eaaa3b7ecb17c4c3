"""Whole plans: the table pipeline, the SQL surface, the registered queries."""
