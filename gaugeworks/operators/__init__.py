"""Relational operators: regions, grouping, canonical rows, checks, metrics, publishing."""
