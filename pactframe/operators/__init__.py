"""Contract rules as DataFrame operators."""
