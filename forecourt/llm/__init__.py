"""Operators that prepare documents for language-model training; nothing else in the library imports them."""
