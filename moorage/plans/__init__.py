"""Whole loads composed from the operators."""
