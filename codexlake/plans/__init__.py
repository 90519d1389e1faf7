"""Registered queries; importing this package registers them all."""

from codexlake.plans import documents, hierarchy, landing, layout, matching, passes, review, rules, scalars, serving, tables, versions, workflow

__all__ = ["documents", "hierarchy", "landing", "layout", "matching", "passes", "review", "rules", "scalars", "serving", "tables", "versions", "workflow"]
