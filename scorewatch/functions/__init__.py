"""Column expressions. Everything here returns a ``Column``; nothing runs
Python per row."""
