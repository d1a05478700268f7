"""Column expressions and the fixed tables that they need."""
