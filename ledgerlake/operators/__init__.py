"""Relational operators: ordered scans, history, facts, metrics, checks."""
