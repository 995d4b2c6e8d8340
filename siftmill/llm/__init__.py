"""Operators that prepare training data for language and surrogate models."""
