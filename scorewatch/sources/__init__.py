"""Table loading (A1-A4, A11), logical-table adapters, sinks."""
