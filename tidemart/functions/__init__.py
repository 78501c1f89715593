"""Column-level functions: times, JSON rows, names, words."""
