"""Column expressions. All of them are built-in functions and stay in generated code."""
