"""Relational operators of the gate."""
