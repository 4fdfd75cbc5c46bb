"""Whole-table plans built from the operators, and the jobs that run them."""
