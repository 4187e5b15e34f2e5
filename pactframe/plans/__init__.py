"""Whole runs: reports over all rules of all tables, issues, create and validate."""
