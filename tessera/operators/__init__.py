"""Operators on relations: books, games, windows, layouts and graphs."""
