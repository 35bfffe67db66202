"""Registered queries and their SQL, one module for each family."""
