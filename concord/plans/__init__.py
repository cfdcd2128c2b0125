"""Registered queries: the operators applied to views of the given tables."""
