"""Column-level functions: everything here is a built-in expression that stays inside code generation."""
