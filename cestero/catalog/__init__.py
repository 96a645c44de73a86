"""Registered queries over the generated tables, with their SQL twins."""
