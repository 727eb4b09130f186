"""Operators for preparing language-model training corpora; nothing else in the library imports this package."""
