"""Column functions and argument parsing."""
