"""Data jobs: what a user calls."""
