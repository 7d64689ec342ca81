"""Composed plans: load inputs, build master, run feature/analytics/model flows."""
