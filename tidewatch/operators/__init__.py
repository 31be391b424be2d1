"""Relational operators of the two rules."""
