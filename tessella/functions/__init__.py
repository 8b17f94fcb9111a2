"""Column expressions and helpers for Python workers."""
