"""Whole-table jobs: the registered queries and the table loads composed from the operators."""
