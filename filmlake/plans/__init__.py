"""Whole queries and flows made of the operators."""
