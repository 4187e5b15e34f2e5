"""Small helpers that build names, types and Column expressions."""
