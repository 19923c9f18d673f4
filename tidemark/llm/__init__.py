"""Operators for training corpora; nothing else of the library imports them."""
