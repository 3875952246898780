"""starloom.sources."""
