"""starloom.operators."""
