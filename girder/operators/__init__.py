"""Relational operators: linking, pass rates, scoring, audiences, upserts, reports."""
