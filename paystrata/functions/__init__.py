"""Column expressions and date ranges shared by the operators."""
