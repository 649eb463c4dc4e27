"""Column-level helpers and record definitions shared by the operators."""
