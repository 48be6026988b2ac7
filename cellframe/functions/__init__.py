"""Parameter parsing, column expressions and p-values."""
