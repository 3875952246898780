"""starloom.plans."""
