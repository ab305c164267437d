"""Registered queries, their SQL twins and the tables they are derived from."""
