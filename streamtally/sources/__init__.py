"""Raw inputs to bronze rows, and bronze rows to tables."""
