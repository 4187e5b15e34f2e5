"""Contract tables, data tables and reports: what is read and written."""
