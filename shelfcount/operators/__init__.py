"""Relational building blocks over the data model."""
