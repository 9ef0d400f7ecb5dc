"""Queries by name; importing a module of this package registers its queries."""
