"""Column helpers and fixed word lists shared by the operators."""
