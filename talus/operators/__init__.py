"""Relational operators: hazard matrix, predicates, matrix join, deduplication, diagnostics."""
