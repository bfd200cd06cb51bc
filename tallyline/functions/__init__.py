"""Column-level helpers and the fixed values shared by operators."""
