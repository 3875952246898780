"""starloom.functions."""
