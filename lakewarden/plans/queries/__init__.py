"""Registered queries by area; importing this package fills the registry."""

from lakewarden.plans.queries import changes, columns, joins, lifecycle, monitor, rules, sources, streams

__all__ = ["changes", "columns", "joins", "lifecycle", "monitor", "rules", "sources", "streams"]
