"""Whole jobs built from the operators, and the queries that check them."""
