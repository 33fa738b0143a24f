"""Reading extract files, landing them once, and reading or writing layer tables."""
