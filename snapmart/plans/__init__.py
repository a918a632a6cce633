"""Whole jobs per kind of entity: flatten, split, merge, rank."""
