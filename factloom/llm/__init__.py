"""Operators for building language-model training data, independent of the rest of the library."""
