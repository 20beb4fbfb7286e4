"""Reusable DataFrame operators (key counts, hierarchy joins, measures, calendar joins, bag difference, upsert)."""
