"""Stage functions that chain operators over a stored dataset."""
