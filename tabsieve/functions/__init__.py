"""Column expressions and small numeric building blocks shared by the operators."""
