"""starloom.streaming."""
