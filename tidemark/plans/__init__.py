"""Registered queries by theme; each entry is (query, oracle SQL or None)."""

from tidemark.plans import expressions, files, governance, history, monitor, nested, relational

THEMES = (history, relational, nested, files, governance, monitor, expressions)
REGISTRY = {name: entry for theme in THEMES for name, entry in theme.QUERIES.items()}
