"""Relational building blocks: quality rules, ordering, history, interval join, layout."""
