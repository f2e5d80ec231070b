"""Operators on texts, names and vectors of training data. Nothing outside this package imports it."""
