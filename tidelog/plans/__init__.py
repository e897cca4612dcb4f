"""End-to-end compositions of the operators."""
