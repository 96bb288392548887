"""Table-agnostic DataFrame operators: keys, columns and batch time are parameters."""
