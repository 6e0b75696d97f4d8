"""Operators for preparing language-model training data at scale; nothing else in the library imports them."""
