"""Reports and query plans built from the operators."""
