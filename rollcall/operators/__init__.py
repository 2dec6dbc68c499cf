"""Relational building blocks of the jobs."""
