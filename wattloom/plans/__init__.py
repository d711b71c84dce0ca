"""Whole jobs made of the operators, and the registered queries."""
