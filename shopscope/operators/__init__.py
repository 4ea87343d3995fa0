"""Reusable DataFrame operators that stay distributed under key skew."""
