"""Relational operators written as DataFrame compositions."""
